"""ledgerloom: retail change batches to a tested star schema, as Spark DataFrame jobs."""
