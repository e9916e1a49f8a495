"""DataFrame → DataFrame operators over readings."""
