"""DataFrame -> DataFrame steps from raw lines to scored customers."""
