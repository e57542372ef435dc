"""Where bars come from and where tables live."""
