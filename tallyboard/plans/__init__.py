"""Input mappings, registered queries and their SQL counterparts."""
