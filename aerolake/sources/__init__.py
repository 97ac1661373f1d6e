"""Places, requests, responses, landed tables and generated users."""
