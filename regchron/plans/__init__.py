"""Gold views, profiling reports and the jobs that put the operators together."""
