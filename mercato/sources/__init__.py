"""Where rows come from: CSV folders, message streams, operational databases."""
