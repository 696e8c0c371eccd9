"""Rule checks on newly landed files."""
