"""Column-level building blocks: log lines, user agents, repeatable picks."""
