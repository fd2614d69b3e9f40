"""Pure ``DataFrame -> DataFrame`` operators: no reading, no writing, no actions."""
