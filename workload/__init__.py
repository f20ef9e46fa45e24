"""The registered queries: raw tables derived from the shared test tables, Spark plans and their SQL twins."""
