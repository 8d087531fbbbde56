"""Named datasets, registered queries and their SQL counterparts."""
