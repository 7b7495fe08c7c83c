"""Functions of columns and names that operators share."""
