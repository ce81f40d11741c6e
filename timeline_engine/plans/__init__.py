"""Domain plans composed of the operators."""
