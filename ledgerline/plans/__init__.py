"""The jobs: dimensions, facts, aggregates, serving queries, runs."""
