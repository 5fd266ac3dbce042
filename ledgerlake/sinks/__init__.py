"""Writers: every one is a distributed write that a replay overwrites instead of doubling."""
