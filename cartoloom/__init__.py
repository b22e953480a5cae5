"""Map features, tiles, key grids and raster cells as Spark DataFrames."""
