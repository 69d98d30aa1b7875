"""Column expressions: cleaning of codes and labels, and indicator measures."""
