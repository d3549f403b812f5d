"""Column functions: coordinates, physics, calendars."""
