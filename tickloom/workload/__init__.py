"""The registered queries: domain tables derived from the test tables, the
queries over them and the SQL their results are compared with."""
