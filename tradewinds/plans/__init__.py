"""The datasets, reports and checks a user asks for."""
