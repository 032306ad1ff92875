"""Reading source files, landing RAW tables, publishing versioned tables."""
