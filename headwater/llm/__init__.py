"""Training-data operators: one module each, whole tables in and out; see ``queries`` for the registered forms."""
