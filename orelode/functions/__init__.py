"""Column expressions. Nothing here touches Python per row."""
