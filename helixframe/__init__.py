"""helixframe: genomic and corpus analytics as PySpark DataFrame transformations."""
