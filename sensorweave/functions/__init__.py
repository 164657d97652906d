"""Column-level building blocks (``Column -> Column``), all JVM-side."""
