"""The four jobs of the package, composed from operators."""
