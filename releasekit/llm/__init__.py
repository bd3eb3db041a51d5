"""Training-data operators.  Nothing else in the library imports this subpackage; its
queries are added by ``__spark_entry__`` when it can be imported."""
