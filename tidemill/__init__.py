"""Market-event and corpus analytics expressed as Spark DataFrame plans."""
