"""Operators that go beyond one built-in expression."""
