"""Jobs composed of the operators: from payloads to features and models."""
