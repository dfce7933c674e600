"""JSON payloads as text: paths, culled keys, and payloads inside HTML pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_OBJECT = "map<string,variant>"
EMPTY_PAYLOAD = "{}"


def json_path(
    payload: Column, *keys: str, type_: str = "string", default: Column | None = None
) -> Column:
    """Value at nested keys; the default where a step is missing, null or no object."""
    path = "$" + "".join(f"['{key}']" for key in keys)
    value = F.try_variant_get(F.try_parse_json(payload), path, type_)
    return value if default is None else F.coalesce(value, default)


def _without(object_: Column, paths: Sequence[tuple[str, ...]]) -> Column:
    dropped = [path[0] for path in paths if len(path) == 1]
    nested: dict[str, list[tuple[str, ...]]] = {}
    for path in paths:
        if len(path) > 1:
            nested.setdefault(path[0], []).append(path[1:])

    kept = F.map_filter(object_, lambda k, _: ~k.isin(dropped)) if dropped else object_
    for head, rest in nested.items():
        kept = F.transform_values(kept, _inside(head, rest))
    return kept


def _inside(head: str, paths: Sequence[tuple[str, ...]]):
    def cull(key: Column, value: Column) -> Column:
        inner = F.try_variant_get(value, "$", _OBJECT)
        culled = F.to_variant_object(_without(inner, paths))
        # anything but an object has no such key
        return F.when((key == head) & inner.isNotNull(), culled).otherwise(value)

    return cull


def cull_payload(payload: Column, paths: Sequence[Sequence[str] | str]) -> Column:
    """Remove top-level or nested keys. Missing paths and bad JSON change nothing."""
    paths = [(p,) if isinstance(p, str) else tuple(p) for p in paths]
    if not paths:
        return payload
    parsed = F.try_variant_get(F.try_parse_json(payload), "$", _OBJECT)
    return F.coalesce(F.to_json(_without(parsed, paths)), payload)


# Scripts and comments in page order. A comment hides the scripts in it.
_SCRIPTS = r"(?s)<!--.*?-->|<(?i:script)\b[^>]*>.*?</(?i:script)\s*>"
_PLAIN_SCRIPT = r"(?s)^<(?i:script)\s*>(window.*?)</(?i:script)\s*>$"
_ASSIGNMENT = r"window\[.*?\]="


def html_to_payload(html: Column, strip_all_semicolons: bool = False) -> Column:
    """The JSON that a page's script assigns to the second property of ``window``.

    The first script without attributes whose body starts with ``window`` counts. No
    such script, or fewer than two assignments, gives an empty object; text that is
    no JSON gives null. Only the closing semicolon is dropped, unless all are asked
    for, also those inside JSON strings.
    """
    scripts = F.regexp_extract_all(html, F.lit(_SCRIPTS), F.lit(0))
    plain = F.get(F.filter(scripts, lambda s: s.rlike(_PLAIN_SCRIPT)), F.lit(0))
    body = F.regexp_extract(plain, _PLAIN_SCRIPT, 1)
    value = F.get(F.split(body, _ASSIGNMENT), F.lit(2))
    if strip_all_semicolons:
        text = F.replace(value, F.lit(";"))
    else:
        text = F.regexp_replace(value, r";\s*$", "")
    text = F.regexp_replace(text, r"^\s+|\s+$", "")
    valid = F.when(F.try_parse_json(text).isNotNull(), text)
    return F.when(value.isNull(), F.lit(EMPTY_PAYLOAD)).otherwise(valid)
