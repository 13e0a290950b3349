"""DataFrame operators over calls and turns."""
