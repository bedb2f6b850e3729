"""Plan building blocks that keep operators safe when one key holds a large share of the rows."""
