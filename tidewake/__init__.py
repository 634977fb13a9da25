"""tidewake: vessel-movement and training-corpus analytics as Spark DataFrame operators."""
