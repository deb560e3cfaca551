"""Match analytics on Spark: raw CSV loads to cleaned tables, facts, marts and a relational target."""
