"""DataFrame-to-DataFrame operators, parametrised by columns and constants."""
