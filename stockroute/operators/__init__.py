"""DataFrame -> DataFrame operators of the allocation flow."""
