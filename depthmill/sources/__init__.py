"""Reading and writing: broker envelopes, lake tables, snapshots, logs."""
