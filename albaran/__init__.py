"""albaran: a PySpark engine for procurement documents and the records drawn from them."""
