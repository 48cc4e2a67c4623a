"""Reading tables and the roles they play in the operators."""
