"""DataFrame operators: joins, cleaning, clustering, redaction, summaries, scoring."""
