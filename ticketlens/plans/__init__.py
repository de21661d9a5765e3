"""Complete jobs: the operators put together."""
