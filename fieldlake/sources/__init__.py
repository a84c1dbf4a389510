"""Where data comes from: tables, loosely formatted soil files, grids, texts, a generator."""
