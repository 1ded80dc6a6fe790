"""Column functions: scalar expressions and JSON documents."""
