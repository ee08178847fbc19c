from foliant.plans.run import main

main()
