"""Reading raw documents and snapshots, routing files, writing results."""
