"""boxoffice."""
