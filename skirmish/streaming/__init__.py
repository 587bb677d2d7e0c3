"""The game session as a keyed stateful operator."""
