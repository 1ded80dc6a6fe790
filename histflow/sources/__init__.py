"""Where rows come from and go to: tables, mappings, staging, versioned snapshots."""
