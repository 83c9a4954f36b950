"""Training-data pipeline operators: ten independent operators, their queries and oracles."""
