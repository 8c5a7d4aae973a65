"""DataFrame-to-DataFrame operators, shared by tables and streams."""
