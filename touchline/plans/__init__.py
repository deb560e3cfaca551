"""The football pipeline: one configuration of the operators."""
