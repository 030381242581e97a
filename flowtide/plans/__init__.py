"""Plan shapes that several operators share: salting, first/last pairs, period windows."""
