"""Independent SQL answers for every registered query, and a tool that compares them."""
