"""How files are cut into tasks."""
