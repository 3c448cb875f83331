"""The engine's operators run over the benchmark tables, each with its SQL twin."""
