"""Column expressions and small driver-side compilers."""
