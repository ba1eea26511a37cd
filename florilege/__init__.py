"""Column-generic DataFrame operators for curating large record catalogues on Spark."""
