"""Personal data: regular expressions propose spans, checks confirm them, words nearby score them.

Only DataFrame functions. A pattern cuts a text into what it matches and what lies between, so the
lengths of both give the places, in code points. Patterns are written so that a search takes
time in proportion to the text: repeats are possessive, and a match starts only where one could not
have started earlier. A text is searched for a kind only if it has the characters that the kind
needs.

Places are running sums of the lengths, taken in chunks, and words nearby are cut out of the text's
bytes, so a text may hold any number of spans.

A null text counts as empty and has no spans. Each row stands alone; repeated rows give repeated
results; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.llm.common import table

EMPTY = ("cast(array() as array<struct<rank:int,kind:string,start:long,end:long,score:double,"
         "byte_start:long,byte_end:long>>)")
#: Code points before and after a span in which words count.
NEAR = 40


def digits_of(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def is_ip(span: Column) -> Column:
    """Four parts of at most 255 each, however many zeros lead."""
    part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.forall(F.split(span, "\\."), lambda p: (F.length(part(p)) <= 3) & (part(p).try_cast("int") <= 255))


def is_luhn(digits: Column) -> Column:
    """From the right, every second digit is doubled; the digit sum ends in 0."""
    reversed_ = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    doubled = F.transform(
        reversed_,
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def is_card(span: Column) -> Column:
    digits = digits_of(span)
    return F.when(F.length(digits).between(13, 19), is_luhn(digits)).otherwise(False)


def is_phone(span: Column) -> Column:
    return F.length(digits_of(span)).between(9, 15)


def is_iban(span: Column) -> Column:
    """Country and check digits moved to the end, letters as 10 to 35: 1 modulo 97."""
    plain = F.regexp_replace(span, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    values = F.transform(
        F.filter(F.split(moved, ""), lambda c: c != ""),
        lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55),
    )
    rest = F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)
    return F.length(plain).between(15, 34) & (rest == 1)


#: Characters of an IBAN by country, as registered.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def iban_pattern() -> str:
    """Exactly as long as the country's IBANs, so what follows is no part; any length for other countries."""
    known = [f"(?:{'|'.join(c.split())})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()]
    other = f"(?!{'|'.join(' '.join(IBAN_LENGTHS.values()).split())})[A-Z]{{2}}[0-9]{{2}}(?:\\x20?[A-Z0-9]){{11,30}}"
    return f"(?<![A-Za-z0-9])(?:{'|'.join([*known, other])})(?![A-Za-z0-9])"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a text without this has no match
    confirmed: Callable[[Column], Column] | None
    words: str  # words that speak for the kind
    score: float  # without such words
    base: bool = True  # all confirmed spans count, whatever their score


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
         None, "mail|contact|write|reach", 0.9),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]",
         is_ip, r"\bip\b|address|host|server|log", 0.6),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]",
         is_card, "card|credit|visa|payment|account", 0.7),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]",
         is_phone, r"phone|call|\btel|mobile|fax", 0.7),
    Kind("iban", iban_pattern(), "[A-Z]{2}[0-9]{2}",
         is_iban, "iban|bank|account|transfer", 0.8, base=False),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "[0-9]-[0-9]{2}-[0-9]",
         None, r"\bssn\b|social security", 0.3, base=False),
)
WITH_WORDS = 0.3
THRESHOLD = 0.5


#: Elements of an array that are summed at once; appending to an array copies it.
CHUNK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value worked out once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def prefixes(size: Column, item: Callable[[Column], Column], zero: Column, kind: str,
             join: Callable[[Column, Column], Column]) -> Column:
    """item(0), then item(0) joined with item(1), and so on: in chunks, whose ends are joined likewise."""
    empty = F.expr(f"cast(array() as array<{kind}>)")
    begin = F.struct(zero.alias("at"), empty.alias("all"))

    def grown(a: Column, x: Column, shown: Column) -> Column:
        return F.struct(join(a["at"], x).alias("at"), F.concat(a["all"], F.array(shown)).alias("all"))

    def chunk(k: Column) -> Column:
        places = F.sequence(k * CHUNK, F.least(k * CHUNK + CHUNK, size) - 1)
        return F.aggregate(places, begin, lambda a, i: grown(a, item(i), join(a["at"], item(i))))

    def spread(chunks: Column) -> Column:
        before = F.aggregate(chunks, begin, lambda a, x: grown(a, x["at"], a["at"]), lambda a: a["all"])
        return let(before, lambda ahead: F.flatten(F.transform(
            chunks, lambda x, k: F.transform(x["all"], lambda v: join(F.get(ahead, k), v)))))

    last = F.floor((size - 1) / CHUNK).cast("int")
    return F.when(size > 0, let(F.transform(F.sequence(F.lit(0), last), chunk), spread)).otherwise(empty)


def _placed(text: Column, pattern: str) -> Column:
    """Matches with their places in code points and bytes."""
    long_ = lambda c: c.cast("long")
    # one more stretch lies between matches than there are matches
    pieces = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, m: F.struct(
            m.alias("m"), long_(F.char_length(gap)).alias("gap"), long_(F.octet_length(gap)).alias("byte_gap"),
            long_(F.char_length(m)).alias("size"), long_(F.octet_length(m)).alias("byte_size")))

    def places(x: Column) -> Column:
        n = F.size(x) - 1
        piece = lambda i: F.get(x, i)
        ends = prefixes(
            n, lambda i: F.struct((piece(i)["gap"] + piece(i)["size"]).alias("at"),
                                  (piece(i)["byte_gap"] + piece(i)["byte_size"]).alias("byte_at")),
            F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("byte_at")), "struct<at:long,byte_at:long>",
            lambda a, v: F.struct((a["at"] + v["at"]).alias("at"), (a["byte_at"] + v["byte_at"]).alias("byte_at")))
        return let(ends, lambda e: F.transform(e, lambda end, i: F.struct(
            piece(i)["m"].alias("m"), (end["at"] - piece(i)["size"]).alias("start"), end["at"].alias("end"),
            (end["byte_at"] - piece(i)["byte_size"]).alias("byte_start"), end["byte_at"].alias("byte_end"))))

    return let(pieces, places)


def _cut(data: Column, begin: Column, size: Column) -> Column:
    """Bytes as text; copies no more than these."""
    return F.substring(data, (begin + 1).cast("int"), size.cast("int")).cast("string")


def spans_of(text: Column, kind: Kind, rank: int) -> Column:
    """Confirmed spans of one kind: array of (rank, kind, start, end, score, byte_start, byte_end).

    The time is in proportion to the text, however many spans it has.
    """
    placed = _placed(text, kind.pattern)
    if kind.confirmed:
        placed = F.filter(placed, lambda x: kind.confirmed(x["m"]))
    wide = F.lit(4 * NEAR).cast("long")  # a code point has four bytes at most

    def scored(data: Column, x: Column) -> Column:
        ahead = F.least(x["byte_start"], wide)
        near = F.lower(F.concat_ws(
            " ", F.right(_cut(data, x["byte_start"] - ahead, ahead), F.lit(NEAR)), F.left(_cut(data, x["byte_end"], wide), F.lit(NEAR))))
        score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(near.rlike(kind.words), WITH_WORDS).otherwise(0.0))
        return F.struct(F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"), x["start"].alias("start"),
                        x["end"].alias("end"), score.alias("score"), x["byte_start"].alias("byte_start"), x["byte_end"].alias("byte_end"))

    found = let(text.cast("binary"), lambda data: F.transform(placed, lambda x: scored(data, x)))
    if not kind.base:
        found = F.filter(found, lambda x: x["score"] >= THRESHOLD)
    return F.when(text.rlike(kind.needs), found).otherwise(F.expr(EMPTY))


def spans(text: Column) -> Column:
    """Spans of all kinds, by kind as listed and then by start."""
    return F.concat(*(spans_of(F.coalesce(text, F.lit("")), k, i) for i, k in enumerate(KINDS)))


def digest(found: Column) -> Column:
    return F.concat_ws(",", F.transform(found, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def redacted(text: Column, found: Column) -> Column:
    """The text with [KIND] for each span; overlapping spans become one, named by the first."""
    by_place = F.array_sort(F.transform(found, lambda x: F.struct(
        x["byte_start"].alias("start"), (-x["byte_end"]).alias("back"), x["rank"].alias("rank"),
        x["byte_end"].alias("end"), F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")).alias("mark"))))
    zero = F.lit(0).cast("long")

    def pieces(data: Column, x: Column, ends: Column) -> Column:
        # how far the spans before a span reach
        passed = lambda i: F.when(i > 0, F.get(ends, i - 1)).otherwise(zero)
        marked = F.transform(x, lambda s, i: F.when(
            s["start"] >= passed(i), F.concat(_cut(data, passed(i), s["start"] - passed(i)), s["mark"])).otherwise(""))
        reached = F.element_at(ends, -1)
        rest = _cut(data, reached, F.octet_length(data).cast("long") - reached)
        return F.concat(F.array_join(marked, ""), rest)

    changed = let(by_place, lambda x: let(
        prefixes(F.size(x), lambda i: F.get(x, i)["end"], zero, "long", lambda a, v: F.greatest(a, v)),
        lambda ends: let(text.cast("binary"), lambda data: pieces(data, x, ends))))
    return F.when(F.size(found) == 0, text).otherwise(changed)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and spans of each document."""
    return docs.select("doc_id", spans(F.col("text")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """Documents with their spans replaced in text; n_chars follows where the text changes."""
    name = "__pii_spans"
    found = docs.withColumn(name, spans(F.col("text")))
    changed = F.size(name) > 0
    out = found.withColumn("text", redacted(F.col("text"), F.col(name)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.drop(name)


def _count(kind: Kind) -> Column:
    # a second parameter of the function, even with a default, would be given the element's index
    return F.size(F.filter("spans", lambda x: x["kind"] == kind.name)).cast("long")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["rank"] < 4)
    counts = [_count(k).alias(f"n_{k.name}") for k in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))
