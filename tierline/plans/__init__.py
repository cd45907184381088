"""Operators put together: cleaning, curating, SQL steps, publishing."""
