"""ledgerline: a Spark-first engine for published notices, ledgers of state, and text corpora."""
