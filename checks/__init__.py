"""The queries registered with the driver, their oracle SQL, and the feed behind both."""
