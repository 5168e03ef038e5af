"""The layers: staging, silver, gold, checks, report feeds and the daily job."""
