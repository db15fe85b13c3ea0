"""Where rows go: checked table writes and text outputs."""
