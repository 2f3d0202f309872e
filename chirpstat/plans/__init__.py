"""Job plans: the batch pipelines and the registered queries."""
