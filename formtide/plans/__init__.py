"""Jobs: compositions of the operators, one lazy plan per layer."""
