"""Where rows come from and go to: delimited shards, tables by path, the catalog."""
