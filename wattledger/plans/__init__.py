"""The three jobs of the engine, built from the operators."""
