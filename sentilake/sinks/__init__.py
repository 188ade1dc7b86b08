"""Writers of snapshots, history, archives, datasets and labelling outputs."""
