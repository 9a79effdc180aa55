"""Fund fundamentals, series and country indicators as Spark DataFrame jobs."""
