"""DataFrame -> DataFrame operators over the enriched order line."""
