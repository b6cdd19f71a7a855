"""Column expressions shared by the operators. No UDFs: everything stays in the JVM."""
