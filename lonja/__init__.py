"""Lonja: a commercial data mart (sales, budget, contact management) as Spark jobs."""
