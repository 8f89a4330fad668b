"""The three batch jobs: bronze, silver, gold."""
