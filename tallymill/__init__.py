"""Count-data ingestion, data quality, marts and metric alerts as Spark DataFrame operators."""
