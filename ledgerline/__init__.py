"""ledgerline: daily-bar market data analytics and corpus preparation, expressed as Spark plans."""
