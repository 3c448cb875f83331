"""Mercato: a Spark lakehouse engine for online-store data.

CSV files and click messages land as raw JSON rows (Bronze), are parsed, typed
and merged by key (Silver), and are served as lazily computed metrics (Gold).
"""
