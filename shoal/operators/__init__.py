"""DataFrame -> DataFrame operators: sequence (skew-safe neighbours), visitors,
logs, cdc (change records), joins, dims (dimension routing), upsert."""
