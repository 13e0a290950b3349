"""Training-data operators that work on raw documents and pages; nothing else in the library imports this subpackage."""
