"""Column-level scalar functions: math, text, time, arrays and maps, UDFs, custom types."""
