"""folioloom: document-block analytics expressed as Spark DataFrame plans."""
