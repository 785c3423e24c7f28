"""evidentia: catalog reconciliation and document evidence as Spark jobs."""
