"""Each module pairs queries over the benchmark tables with equivalent SQL."""
