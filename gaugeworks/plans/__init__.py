"""Layer loads and the reports over them."""
