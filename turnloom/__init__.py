"""turnloom: conversational-corpus curation and training-data preparation on PySpark."""
