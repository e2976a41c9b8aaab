"""The library's operators applied to named tables, each beside the SQL that it must agree with."""
