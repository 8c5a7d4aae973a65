"""Where trades and alerts come from."""
