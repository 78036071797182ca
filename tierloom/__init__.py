"""Customer-segmentation analytics as PySpark DataFrame transformations."""
