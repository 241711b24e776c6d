"""Plan shapes shared by the operators: time grids, tiles with halos, exact quantiles."""
