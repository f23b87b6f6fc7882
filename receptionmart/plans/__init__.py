"""Jobs, views and analyses composed from the operators."""
