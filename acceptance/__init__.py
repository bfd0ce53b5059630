"""One checkable query per operator, and the SQL each is checked against."""
