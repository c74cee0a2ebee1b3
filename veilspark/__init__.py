"""veilspark: document de-identification, entity resolution and corpus preparation on Spark."""
