"""Jobs made of operators, and the queries registered on the test tables."""
