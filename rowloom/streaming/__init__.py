"""Arriving records. The flows of this package are snapshots: document frequencies, components and splits depend on all
rows. What depends on one row only can run on a stream; `arrivals` holds it."""
