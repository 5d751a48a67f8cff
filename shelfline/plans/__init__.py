"""The jobs, layer by layer: staging, bronze, silver, features, gold."""
