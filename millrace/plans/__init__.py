"""Plan shaping shared by the operators: hot groups, scratch storage, reports."""
