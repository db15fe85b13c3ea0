"""Where rows come from: tables, partitions, delimited text."""
