"""Training-data operators: tokens, secrets, decontamination, dedup, toxicity,
personal data, language-model scores and quality rules, as Spark jobs."""
