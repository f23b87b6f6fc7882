"""Reception mart: relates critics' reviews to listening figures with PySpark."""
