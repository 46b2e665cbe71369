"""Where rows come from."""
