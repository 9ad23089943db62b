"""A batch e-commerce data mart written as PySpark DataFrame plans."""
