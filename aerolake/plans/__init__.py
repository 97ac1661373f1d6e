"""Jobs made of operators, and the queries bound to the test tables."""
