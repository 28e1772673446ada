"""From staging tables to curated tables, exceptions, answers and checks."""
