"""Where rows come from: topics, raw tables, imported files."""
