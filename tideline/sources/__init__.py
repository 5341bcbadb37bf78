"""Where rows come from: change logs, snapshots, seeds, metric texts and JSON reports."""
