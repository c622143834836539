"""DataFrame -> DataFrame operators. Each function is lazy; none collects."""
