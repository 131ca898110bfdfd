"""State transitions and reports as pure functions over the jobs and workers tables."""
